"""Readers and writers: given tables, the symbol dimension, landed responses,
Bronze / Silver / Gold sinks."""
