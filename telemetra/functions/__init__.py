"""Column-level scoring functions (pure expressions, JVM-side)."""

from telemetra.functions.scoring import *  # noqa: F401,F403
