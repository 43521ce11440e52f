"""Scalar functions: native expressions, and Arrow functions where no native expression is exact."""
