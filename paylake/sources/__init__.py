"""Where rows come from: message streams and the stored layers."""
