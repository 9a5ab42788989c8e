"""terrace: layered raw -> clean -> metrics tables as plain Spark jobs.

Everything here is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql`` primitives; the energy tables under ``plans/energy`` are
configurations of those functions.
"""
