"""Airline on-time analytics as plain Spark DataFrame functions.

``sources``    monthly extracts, the partitioned lake, reference lookups
``functions``  column expressions: strict casts, surrogate keys, source codes
``operators``  DataFrame -> DataFrame steps: staging, legs, labels, profiles
``plans``      the flight fact, the calendar dimension and the delay marts
"""
