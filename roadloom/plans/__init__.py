"""Bindings of the operators to the driver's tables, their SQL oracles, plan checks."""
