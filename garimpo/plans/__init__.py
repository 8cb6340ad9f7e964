"""The dealership: its fixed values, its three layers, its proofs and its dashboard datasets."""
