"""Named query plans. Importing this package registers every query."""

from . import archive, export, harvest, landed, reports, runs, streams, texts  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
