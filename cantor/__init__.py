"""Read-along alignment analytics, declared as Spark plans."""

__version__ = "0.1.0"
#: Public modules; each operator is a function of one of them.
__all__ = ["align", "anchoring", "config", "document", "emission", "epub", "gate", "metrics", "overlay", "pipelines", "recording", "reshape", "timeline", "words"]


def __getattr__(name: str):
    from importlib import import_module

    if name in __all__:
        for package in ("cantor.operators", "cantor.sources", "cantor"):
            try:
                return import_module(f"{package}.{name}")
            except ModuleNotFoundError as e:
                if e.name != f"{package}.{name}":
                    raise
    raise AttributeError(f"module 'cantor' has no attribute {name!r}")
