"""Column expressions. Each returns a ``Column`` that stays inside generated code."""
