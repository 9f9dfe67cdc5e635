"""Derived column names (one rule each, lower case)."""


def previous_name(col: str) -> str:
    return f"{col}_previous"


def change_name(col: str) -> str:
    return f"{col}_change"


def sma_name(col: str, periods: int) -> str:
    return f"{col}_sma_{periods}"


def crossover_name(trend_col: str) -> str:
    return f"{trend_col}_co"
