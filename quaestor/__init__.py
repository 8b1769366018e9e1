"""Question-answer dataset construction and scoring over filing corpora, on Spark."""

from quaestor.options import Options
from quaestor.session import build_session

__all__ = ["Options", "build_session"]
