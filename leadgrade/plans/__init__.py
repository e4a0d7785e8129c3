"""Reusable plan shapes: size checks, global order without one-task windows."""
