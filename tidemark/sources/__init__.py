"""Scans, bindings of the driver tables to logical inputs, and sinks."""
