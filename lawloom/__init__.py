"""Legislative text analytics as Spark DataFrame operators."""

from lawloom import functions, operators, plans, rules, schemas, settings, sinks, sources

__all__ = ["functions", "operators", "plans", "rules", "schemas", "settings", "sinks", "sources"]
