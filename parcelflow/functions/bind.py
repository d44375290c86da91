"""Bind an expression once inside higher-order-function code.

Spark evaluates higher-order functions (``transform``, ``filter``, ``aggregate``) without
whole-stage codegen, so a sub-expression that appears several times in a lambda body is
computed several times per element.  ``let(value, body)`` evaluates ``value`` once and hands
it to ``body`` as a lambda variable (a one-element ``transform``), which keeps the per-step
cost of array walks linear.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` (evaluated once)."""
    return F.element_at(F.transform(F.array(value), body), 1)
