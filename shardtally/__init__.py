"""App-event analytics on Spark: day-sharded events with key/value attributes.

``sources``    reading shards and listing them
``functions``  column helpers (key lookup, UTC time, text, ratios, date windows)
``operators``  DataFrame in, DataFrame out
``plans``      the ready-made reports
``checks``     fixtures and one checked query per operator
"""
