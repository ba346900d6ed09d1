"""Imports every query module, so that QUERIES and ORACLES are complete."""

from tidelog.plans import decoding, measures, scans, state, streams, writing  # noqa: F401
from tidelog.plans.catalog import ORACLES, QUERIES  # noqa: F401
