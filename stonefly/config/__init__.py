"""Configuration tables (fixed values): score curves, methods, corrections,
descriptions, staging template and validation rule sets."""
