"""DataFrame operators, by stage of the revenue model."""
