"""Analytics over simulation ensembles (sets x runs x ticks x agents) as Spark DataFrame jobs."""

__version__ = "0.1.0"
