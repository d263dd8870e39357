"""Scalar column expressions (pure Catalyst, no UDFs)."""

from claimlens.functions.exprs import *  # noqa: F401,F403
