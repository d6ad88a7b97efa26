"""Column-level building blocks (scalar functions X-01..X-24)."""

from editsurge.functions.scalar import *  # noqa: F401,F403
