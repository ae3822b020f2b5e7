"""Registered queries: every operator family run over the given tables.

Each module registers a Spark job together with the equivalent SQL. Importing
this package fills the registry.
"""

from sheafwork.queries.registry import REGISTRY, Query, query, table  # noqa: F401
from sheafwork.queries import panel  # noqa: F401,E402
from sheafwork.queries import relational  # noqa: F401,E402
from sheafwork.queries import aggregates, ordered  # noqa: F401,E402
from sheafwork.queries import collections, scalars  # noqa: F401,E402
from sheafwork.queries import landed  # noqa: F401,E402
from sheafwork.queries import checks, orders, versioned  # noqa: F401,E402
from sheafwork.queries import streams  # noqa: F401,E402
from sheafwork.queries import pythonic  # noqa: F401,E402
from sheafwork.queries import layers  # noqa: F401,E402
