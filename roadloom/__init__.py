"""roadloom: fleet and mobility analytics as Spark DataFrame operators.

Every public operator takes DataFrames plus column-name parameters and returns a
lazy DataFrame; Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"
