"""Page sources. Importing this package registers the built-in ones."""

from pagelarder.sources import (  # noqa: F401
    pingo_doce,
    receitas_portugal,
    sabor_intenso,
    sapo_sabores,
    teleculinaria,
    vaqueiro,
)
from pagelarder.sources.spec import Links, SourceSpec, register_source, registered_sources

__all__ = ["Links", "SourceSpec", "register_source", "registered_sources"]
