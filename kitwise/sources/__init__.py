"""Inputs (tables, stand-ins, drift-tolerant reads) and sinks."""
