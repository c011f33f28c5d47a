"""pcmarts: property-and-casualty insurance marts on Spark DataFrames."""

from pcmarts.workspace import Workspace

__all__ = ["Workspace"]
