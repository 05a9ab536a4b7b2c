"""The driver's tables in the shape of the fund data, and one check per operator."""
