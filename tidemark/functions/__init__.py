"""Column-expression helpers (JVM-side, codegen friendly)."""
from tidemark.functions.exprs import *  # noqa: F401,F403
