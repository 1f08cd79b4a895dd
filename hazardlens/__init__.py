"""Spark-native inspection-risk analytics: clean, parse violation text, score establishments, serve queries.

Main entry points::

    from hazardlens import job_session, read_pages, run_transform, Dashboard, Filters
"""

from .plans.batch import run_transform, transform
from .plans.dashboard import Dashboard, Filters
from .session import build_session, job_session
from .sources.files import read_csv_by_header, read_raw_csv
from .sources.landed import land_pages, read_pages

__version__ = "0.1.0"

__all__ = ["Dashboard", "Filters", "build_session", "job_session", "land_pages", "read_csv_by_header",
           "read_pages", "read_raw_csv", "run_transform", "transform"]
