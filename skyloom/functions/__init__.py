"""Column functions: the tile grid, keys, calibration and band mathematics."""
