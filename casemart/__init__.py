"""casemart: from messy case-level records to a published, checked analytical mart, on Spark."""

from casemart.config import Layout, Settings
from casemart.domain import CaseDomain

__all__ = ["CaseDomain", "Layout", "Settings"]
