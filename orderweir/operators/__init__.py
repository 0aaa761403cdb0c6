"""Operators: frames in, frames out. The ones without windows or joins run on streams too."""
