"""tidewatch: hazard and risk analytics as Spark DataFrame operators.

Layout
------
functions/   Column builders (text, maths, time, arrays, geo)
sources/     readers for landed JSON envelopes, lookups, and the bindings
             that map the driver's test tables onto domain entities
operators/   DataFrame -> DataFrame operators (cleaning, series, spatial,
             scoring, census, alerts, validation, quality)
plans/       end-to-end compositions (station features -> area hazard ->
             scored indices -> products) and the query registry
sinks/       CSV / Parquet / GeoJSON writers, full-refresh publish
streaming/   Structured Streaming variants of the batch operators
"""
from tidewatch.session import get_spark, stage_checkpoint  # noqa: F401
