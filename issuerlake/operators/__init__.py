from issuerlake.operators.balances import *  # noqa: F401,F403
from issuerlake.operators.catalog import *  # noqa: F401,F403
from issuerlake.operators.checks import *  # noqa: F401,F403
from issuerlake.operators.chunks import *  # noqa: F401,F403
from issuerlake.operators.debentures import *  # noqa: F401,F403
from issuerlake.operators.frames import *  # noqa: F401,F403
from issuerlake.operators.issuer import *  # noqa: F401,F403
from issuerlake.operators.multisets import *  # noqa: F401,F403
from issuerlake.operators.search import *  # noqa: F401,F403
from issuerlake.operators.sinks import *  # noqa: F401,F403
from issuerlake.operators.statements import *  # noqa: F401,F403
from issuerlake.operators.summaries import *  # noqa: F401,F403
from issuerlake.operators.temporal import *  # noqa: F401,F403
