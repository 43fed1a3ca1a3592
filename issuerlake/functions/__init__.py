from issuerlake.functions.clean import *  # noqa: F401,F403
from issuerlake.functions.vectors import *  # noqa: F401,F403
