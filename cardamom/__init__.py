"""cardamom: retail and card-payment analytics written as Spark jobs."""

__version__ = "0.1.0"
