from .tables import Sources, inline

__all__ = ["Sources", "inline"]
