"""Column-expression helpers (all JVM-side, codegen'd)."""

from loadlens.functions.columns import cut, div, flag, mean_of, sample_std_of  # noqa: F401
