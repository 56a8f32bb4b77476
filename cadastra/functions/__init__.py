"""Column expressions: money rules, billing dates, text helpers."""
