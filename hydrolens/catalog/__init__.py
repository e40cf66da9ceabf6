"""Named queries over the given tables, each with the SQL another engine can check it with."""

from hydrolens.catalog import images, jobs, maintenance, monitoring, prices, uploads  # noqa: F401
from hydrolens.catalog.registry import oracle, queries  # noqa: F401
