"""surveyfold: weighted survey-microdata tables on Spark DataFrames.

Person-level records with a weight go in; weighted population, employment and
labour-force counts by geography x occupation x industry x birth status come
out. Everything is DataFrame / SQL work that Catalyst plans: native
expressions, conditional aggregates, broadcast joins of size-bounded
dimensions, and one finest cube (no self-joins) that every roll-up reuses.

Layout
    functions/  scalar rules (padding, canonical keys, R-like NA handling,
                code derivations)
    operators/  measures, joins, apportionment, roll-ups, quality checks
    sources/    codebook + fixed-width scan, typed CSV readers, sinks, panels
    plans/      products T0-T16 / V1 and the binding to the driver tables
    streaming/  incremental panel build with Structured Streaming
"""

__all__ = ["Survey", "build_tables", "publish_tables", "__version__"]
__version__ = "0.1.0"


def __getattr__(name):
    # lazy, so importing a submodule does not pull in the whole package
    if name == "Survey":
        from .plans.products import Survey
        return Survey
    if name == "build_tables":
        from .plans.build import build_tables
        return build_tables
    if name == "publish_tables":
        from .plans.build import publish_tables
        return publish_tables
    raise AttributeError(name)
