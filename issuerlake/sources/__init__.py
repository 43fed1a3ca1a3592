from issuerlake.sources.delimited import *  # noqa: F401,F403
from issuerlake.sources.filings import *  # noqa: F401,F403
from issuerlake.sources.macro import *  # noqa: F401,F403
from issuerlake.sources.markup import *  # noqa: F401,F403
