"""Column-to-column helpers; everything here stays in the JVM unless a docstring says otherwise."""

from arealoom.functions.labels import *  # noqa: F401,F403
from arealoom.functions.measures import *  # noqa: F401,F403
from arealoom.functions.periods import *  # noqa: F401,F403
from arealoom.functions.text import *  # noqa: F401,F403
