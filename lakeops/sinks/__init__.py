"""Writers K1-K8."""
