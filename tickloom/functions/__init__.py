"""Column functions: null-safe arithmetic and rolling kernels."""
