"""Analytical plans over a published star: views, statements, measures, page datasets and the batch run."""
