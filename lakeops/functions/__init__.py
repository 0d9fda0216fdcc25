"""Column expressions shared by the jobs (all built-in Spark functions)."""
from .exprs import *  # noqa: F401,F403
