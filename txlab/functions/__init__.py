"""Column expressions. All of them stay in the JVM."""

from .expr import (
    hash_hex, is_missing, logistic, normal, numeric_columns, present, ratio, rounded, string_columns, uniform,
)
from .ks import exact_two_sample, kolmogorov_tail, normal_cdf, normal_pdf

__all__ = [
    "exact_two_sample", "hash_hex", "is_missing", "kolmogorov_tail", "logistic", "normal", "normal_cdf", "normal_pdf", "numeric_columns",
    "present", "ratio", "rounded", "string_columns", "uniform",
]
