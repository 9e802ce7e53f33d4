"""Column functions (native expressions) and the numeric kernels behind the Arrow UDFs."""
