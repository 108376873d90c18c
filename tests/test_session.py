from __future__ import annotations

from bazaarline.session import TASK_SIZES, prepare

KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_tasks_are_sized_where_the_cluster_names_no_size(spark):
    session = spark.newSession()
    session.conf.unset(KEY)
    prepare(session)
    assert session.conf.get(KEY) == TASK_SIZES[KEY] == "16m"
    session.conf.set(KEY, "8m")
    prepare(session)
    assert session.conf.get(KEY) == "8m"
