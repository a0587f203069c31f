"""Operators of a training-data pipeline.  Nothing else in the library
imports this package; its queries reach the entry point through
:mod:`cadenza.llm.queries`."""
