"""Named queries."""

from . import registry

registry.load()
