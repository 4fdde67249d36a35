"""Wiring: relations of the lake, materialisation and exports."""
