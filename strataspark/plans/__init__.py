from . import assets, chains, closing, density, evaluation, extended, frames, gating, graphs, intake, matching, paths, planning, profiles, recovery, robust, trackgraph  # noqa: F401  each registers its queries
