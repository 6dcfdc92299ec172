from assetqueue.functions.expressions import *  # noqa: F401,F403
from assetqueue.functions.prefix import prefix_sum, day_number  # noqa: F401
