"""Every operator as a query over the supplied tables, with an equal SQL text where there is one."""

from suite.registry import QUERIES, SQL  # noqa: F401
from suite import catalogue, cooccurrence, counts, evaluation, factors, lists, vectors  # noqa: F401, E402
