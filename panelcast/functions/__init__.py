from panelcast.functions.expressions import *  # noqa: F401,F403
