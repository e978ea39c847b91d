"""DataFrame -> DataFrame operators."""

from . import audit, calendar, enrich, ordered, quality, ranking, reshape, schema, semistructured, upsert  # noqa: F401
