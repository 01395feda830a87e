"""Contact-centre analytics mart built from PySpark DataFrame operators."""

from contact_mart.params import Params
from contact_mart.session import Workspace, tune

__all__ = ["Params", "Workspace", "tune"]
