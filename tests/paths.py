"""Folders of the given tables, for tests at any depth."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
