"""Composed jobs: each is one lazily planned DataFrame graph over all districts."""
