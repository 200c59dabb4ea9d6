"""Column functions: projection, axial coordinates, geodesy, statistics."""
