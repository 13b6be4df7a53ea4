"""Column builders: every predicate and projection is a plain ``Column``
expression over built-in functions, so it stays inside whole-stage codegen
and can be pushed down / fused by Catalyst."""

from tellus.functions.predicates import *  # noqa: F401,F403
from tellus.functions.scalars import *  # noqa: F401,F403
