"""Named queries over the test tables, and the SQL each of them equals."""

from .plans import curation, files, links, matching, pixels, scoring, streams

_PLANS = (curation, files, links, matching, pixels, scoring, streams)
QUERIES = {name: query for plan in _PLANS for name, query in plan.QUERIES.items()}
ORACLES = {name: sql for plan in _PLANS for name, sql in plan.ORACLES.items()}
