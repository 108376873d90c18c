from __future__ import annotations

import pytest

# Columns with the names that operators use inside.
CLASHES = (
    "doc tag hash position part kind keep kept docs n_words base_failed host rejected node bucket vector order told "
    "row copy turn mix_size mix_hash mix_start words size taken target slots source_size start ids width file first "
    "n_tokens at item shape pairs tokens digest refers_to record_id expression short rule verdict license coverage"
).split()


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Null, empty and blank texts, a null id, repeated rows, copies, ties and a long text."""
    line = "The quick brown fox jumps over the lazy dog near the river bank today."
    other = "Une phrase en français, avec des accents éèê et 3.5 kg de pommes pour Marie."
    long = " ".join(f"word{k % 997} and{k}" for k in range(6000))
    return [
        (1, line, "en", "a"),
        (1, line, "en", "a"),
        (2, line, "en", None),
        (3, None, None, "a"),
        (4, "", "en", "b"),
        (5, " \t\n ", "en", "b"),
        (None, line + "\n" + other, "en", "c"),
        (None, None, None, None),
        (6, other, "fr", "c"),
        (6, other + " Encore.", "fr", "c"),
        (7, long, "en", "a"),
        (8, long + " end", "en", "b"),
        (9, "\n".join([line] * 60), "en", "z"),
        (10, "<|endoftext|> x\x00y \u0130. \U0001f642 ''' 's", "xx", "z"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """``documents`` with the odd rows and clashing columns."""
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    rows = [(*r, len(r[1] or ""), *["?"] * len(CLASHES)) for r in odd_rows]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def sample(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def answers():
    """Rows of DuckDB SQL over given tables."""
    import duckdb

    def run(sql: str, **tables):
        connection = duckdb.connect()
        for name, table in tables.items():
            connection.register(name, table)
        found = connection.execute(sql)
        names = [c[0] for c in found.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted((tuple(r[k] for k in order) for r in found.fetchall()), key=repr)

    return run


@pytest.fixture(scope="session")
def result():
    """Rows of a DataFrame, columns in order of their names."""

    def read(df):
        names = sorted(df.columns)
        return sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)

    return read
