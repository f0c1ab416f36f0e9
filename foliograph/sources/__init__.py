"""Inputs and outputs: files, page JSON, images, providers, chunk tables."""
