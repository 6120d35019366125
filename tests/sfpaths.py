"""Paths of the driver's tables that several test modules use."""

SF001 = "/root/testdata/sf0.001"
