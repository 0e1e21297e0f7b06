"""Inputs: the driver's tables, the model adapters, fixed reference lists, feeds."""
