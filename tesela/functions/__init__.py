"""Column functions: Column in, Column out, all evaluated inside the JVM."""

from .classes import *  # noqa: F401,F403
from .exact import *  # noqa: F401,F403
from .parse import *  # noqa: F401,F403
