"""Column expressions and scalar kernels."""
