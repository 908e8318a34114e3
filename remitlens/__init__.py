"""Revenue-cycle analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``) built from Spark SQL
expressions. Nothing runs until an action, except where a docstring says so (model fitting, sinks).
"""
