"""quillpanel: longitudinal survey data processing as declarative Spark plans."""

__version__ = "0.1.0"
