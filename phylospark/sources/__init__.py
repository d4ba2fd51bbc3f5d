"""Readers of the file formats, and writers back to them."""

from .read import *  # noqa: F403
from .write import *  # noqa: F403
