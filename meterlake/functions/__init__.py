from meterlake.functions.expressions import *  # noqa: F401,F403
from meterlake.functions.rules import *  # noqa: F401,F403
