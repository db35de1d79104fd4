"""Imports every query module so that the registry is filled."""

from tabrix.plans import q_encoders  # noqa: F401
from tabrix.plans import q_scalar  # noqa: F401
from tabrix.plans import q_relational  # noqa: F401
from tabrix.plans import q_sampling  # noqa: F401
from tabrix.plans import q_metrics  # noqa: F401
from tabrix.plans import q_models  # noqa: F401
from tabrix.plans import q_recipes  # noqa: F401
from tabrix.plans import q_docs  # noqa: F401
from tabrix.plans import q_prepared  # noqa: F401
