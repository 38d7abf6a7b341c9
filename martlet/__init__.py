"""Martlet: retail warehouse jobs, reports, checks and models as Spark plans."""

from martlet.session import build_session, tune
from martlet.sources.mart import Mart

__all__ = ["Mart", "build_session", "tune"]
