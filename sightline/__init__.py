"""Search and AI-visibility analytics as Spark jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function.  ``bindings`` connects the operators to
concrete tables and pairs each one with the SQL it must agree with.
"""
