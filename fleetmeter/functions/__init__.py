"""Column functions: time buckets, safe casts, rounding, masking, payload fields."""
