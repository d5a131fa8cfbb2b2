"""The lake: datasets, audits, publishing, and readers of vendor formats."""
