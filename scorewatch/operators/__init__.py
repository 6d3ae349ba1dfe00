"""Operators: dedup, trailing velocity, SCD2 snapshot, as-of join, dense ids,
alert rules and data-quality checks. Each is a DataFrame -> DataFrame
function made of stock Spark operators."""
