"""Column expressions shared by the operators."""

from askgraph.functions.columns import (
    in_hash_sample,
    int_or_zero,
    required,
    split_tags,
    strict_int,
    whole_number,
)

__all__ = ["in_hash_sample", "int_or_zero", "required", "split_tags", "strict_int", "whole_number"]
