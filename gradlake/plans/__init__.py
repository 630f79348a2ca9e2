"""Training plans: batch moments, affine maps, fitting, sweeps."""
