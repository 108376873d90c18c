"""Registered queries over the sample tables and the SQL that checks them."""

# The smallest sample, read by the tests.
SAMPLE = "/root/testdata/sf0.001"
