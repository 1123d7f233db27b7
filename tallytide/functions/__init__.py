from tallytide.functions.expressions import (
    absolute,
    cpm,
    element,
    log2fc,
    log2p1,
    quoted,
    to_count,
    to_int,
)

__all__ = ["absolute", "cpm", "element", "log2fc", "log2p1", "quoted", "to_count", "to_int"]
