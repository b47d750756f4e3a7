"""Column-to-Column building blocks; everything here stays inside whole-stage codegen,
except the Arrow similarity kernel in :mod:`tarifold.functions.similarity`."""
