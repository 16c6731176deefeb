"""Whole plans: cleaning, warehouse, views, quality, serving and the daily run."""
