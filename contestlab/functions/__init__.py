from contestlab.functions.text import *  # noqa: F401,F403
from contestlab.functions.values import *  # noqa: F401,F403
