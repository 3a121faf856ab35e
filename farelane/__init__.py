"""Taxi-trip analytics as Spark DataFrame operators.

Sub-packages:

- ``functions``  Column builders (time, geography, encoding)
- ``operators``  DataFrame -> DataFrame steps (cleaning, features, profiling)
- ``sources``    reading, writing and cataloguing trip tables
- ``plans``      multi-step jobs: preprocess, train, evaluate, score, registry
- ``streaming``  the same steps over Structured Streaming sources
- ``suite``      the registered queries and the SQL they are checked with
"""
