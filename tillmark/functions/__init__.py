from tillmark.functions.money import *  # noqa: F401,F403
from tillmark.functions.scalars import *  # noqa: F401,F403
