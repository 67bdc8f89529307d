"""Column builders; every one is a composition of JVM expressions."""

from palimpsest.functions.scalars import *  # noqa: F401,F403
from palimpsest.functions.timestamps import *  # noqa: F401,F403
