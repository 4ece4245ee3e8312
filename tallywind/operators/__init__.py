"""DataFrame operators: frames in, frames out, no actions."""
