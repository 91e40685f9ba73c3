"""Text search and text counting as Spark jobs.

The public surface is re-exported here; see the README for a tour.
"""

from termloom.plans.index import IndexStats, TextIndex, build_index, load_index
from termloom.plans.mention_report import mention_report
from termloom.plans.search import SearchResult, search, search_term
from termloom.plans.workspace import Workspace
from termloom.profiles import NORMALIZED, RAW, SMOOTHED, Profile

__all__ = [
    "NORMALIZED",
    "RAW",
    "SMOOTHED",
    "IndexStats",
    "Profile",
    "SearchResult",
    "TextIndex",
    "Workspace",
    "build_index",
    "load_index",
    "mention_report",
    "search",
    "search_term",
]
