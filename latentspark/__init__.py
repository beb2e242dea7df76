"""Latent-space analytics on Spark DataFrames: ordered particle tables, their
latent vectors, and the image, volume and run tables around them."""

__version__ = "0.1.0"
