"""Campaign analytics on Spark: job tables, log extraction, reconciliation and reports as DataFrame plans."""

__version__ = "0.1.0"
