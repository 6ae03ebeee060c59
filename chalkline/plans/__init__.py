"""Cleaning plans, warehouse views, the risk index and the reports."""
