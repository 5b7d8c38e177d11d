"""Ratings analytics on Spark: clean, join and summarise rated catalogues.

Public functions take and return DataFrames, and a report is a DataFrame too; nothing is printed. Most are lazy. Those that
choose a plan by the size of their input (``gold``, ``ratings_of_title``, ``split_join``, ``measured_bytes``) run a counting
job when called, of which single numbers reach the driver, and those that store a table write it when called.
"""

from starledger import functions, operators, plans, sources
from starledger.session import build_session, shared_folder

__all__ = ["build_session", "functions", "operators", "plans", "shared_folder", "sources"]
