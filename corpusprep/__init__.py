"""Conversation-corpus preparation as Spark DataFrame transforms."""

import sys

from pyspark import cloudpickle

from corpusprep.session import build_session

# Workers get the few Python helpers with the plan and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
