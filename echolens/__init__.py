"""echolens: conversation-emotion analytics as Spark DataFrame jobs.

Layout
------
sources/    readers, inline lookups, writers
functions/  column builders (calendar, emotions, text, geo, profile)
operators/  DataFrame -> DataFrame operators (lift, shares, dedupe, ranking,
            search, tokens, phrases, topics, coherence, scoring)
plans/      bindings to tables, consolidation, reports, the query catalog
streaming/  Structured Streaming jobs
"""

__version__ = "0.1.0"
