"""All registered queries; importing the plan modules fills the registry."""

from svgspark.plans import caption, clean, mining, normalize, streaming, train, tree  # noqa: F401
from svgspark.plans.registry import ORACLE, QUERIES  # noqa: F401
