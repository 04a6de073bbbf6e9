"""The given tables the tests read."""

DATA = "/root/testdata/sf0.001"
