"""Readers of the headerless text inputs, artefacts in shared storage, and logical views of the driver's tables."""
