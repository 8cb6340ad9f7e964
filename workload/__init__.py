"""Queries over the driver tables and the SQL that checks them."""

from workload.dealership import QUERIES as _DEALERSHIP
from workload.failing import QUERIES as _FAILING
from workload.generic import QUERIES as _GENERIC

ALL = [*_GENERIC, *_DEALERSHIP, *_FAILING]
