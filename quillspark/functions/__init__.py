from quillspark.functions.scalars import *  # noqa: F401,F403
from quillspark.functions.acl import *  # noqa: F401,F403
