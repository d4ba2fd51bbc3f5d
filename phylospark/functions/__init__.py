"""Column functions: sequence text, identifiers and small numeric forms."""

from .sequence import *  # noqa: F403
from .sequence import __all__ as __all__
