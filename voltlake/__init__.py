"""voltlake: energy-market and weather analytics as Spark DataFrame/SQL plans."""

__version__ = "0.1.0"
