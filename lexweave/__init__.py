"""lexweave: text corpora, instruction data and language-model evaluation as Spark jobs."""

__version__ = "0.1.0"
